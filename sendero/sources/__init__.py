"""Sources, sinks and staging."""
