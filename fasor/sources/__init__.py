"""Sources and sinks: ZIP exports, stored tables, registry files, CSV output."""
