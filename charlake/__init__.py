"""Chat-log analytics on Spark: user roll-ups, typed tables with token counts, feedback matching."""
