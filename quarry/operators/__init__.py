"""The reference's batch jobs re-expressed as DataFrame operators."""
