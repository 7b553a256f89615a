"""DataFrame operators over the six telemetry signals."""
