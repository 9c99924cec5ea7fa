"""Sources: the derived record feed, raw CSV rows, replays, samples and stream source options."""
