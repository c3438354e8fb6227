"""Sources and sinks.

tables      S1-S6, S10, S12 scans (parquet, CSV with missing tokens, JSON
            documents), sinks, bounded preview, path checks
versions    S5-S9, S11 versioned snapshots with a manifest, change feed,
            new-rows-only loads
"""
