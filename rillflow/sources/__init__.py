"""Sources: file discovery, whole-file JSON scans, record normalisation, history reads."""
