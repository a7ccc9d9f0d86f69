"""Readers and writers: raw files, bronze, seeds, JDBC, versioned tables, crawled pages."""
