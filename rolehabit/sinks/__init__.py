"""Writers of alerts and of the quarantine."""
