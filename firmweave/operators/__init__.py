"""DataFrame-to-DataFrame steps: clean, match, harmonise, report, derive features."""
