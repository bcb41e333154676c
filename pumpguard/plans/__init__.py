"""Job entry points composed from sources, operators and sinks."""
