"""Sources and sinks: file readers/writers and fixture views over the driver tables."""
