"""Sources: JSON log files (batch and stream), pattern lists, driver-table views."""
