"""The reference's "streaming" is the stdin/stdout pipe protocol of MapReduce
streaming (X5), not stream processing: it has no watermarks, windows or state,
so nothing here uses Structured Streaming."""
