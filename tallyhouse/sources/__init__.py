"""Sources and sinks: staging CSV readers, the driver-table adapter and table storage."""
