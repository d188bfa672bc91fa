"""Writers: text/TSV, ordered output, versioned keyed tables, and the custom binary layouts."""
