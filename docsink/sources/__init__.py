"""Sources and sinks: change records in, bulk calls, state and rejects out."""
