"""The load as a stream over landed files."""
