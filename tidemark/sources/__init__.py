"""Sources and sinks: the testdata adapter, raw-reply decoders and the bar store."""
