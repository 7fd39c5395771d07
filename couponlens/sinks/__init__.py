"""Report outputs: ordered series, daily records, manifest, change detection."""
