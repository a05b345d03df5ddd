"""Raw file scans, staging areas and the flat frames built from the test tables."""
