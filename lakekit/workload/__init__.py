"""The registered queries: the library's operators over the supplied tables."""
