"""Sources and sinks: landing CSV, layer tables, driver-table fixtures."""
