"""Sources and sinks around the operators."""
