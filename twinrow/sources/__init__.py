"""Sources and sinks: CSV, text, topics of JSON records."""
