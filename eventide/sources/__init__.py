"""Sources and sinks: driver tables, stand-in fixtures, topic codecs, CSV ingest, layouts."""
