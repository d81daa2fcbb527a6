"""Writers: files and lake tables."""
