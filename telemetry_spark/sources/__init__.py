"""Reading pending reports and writing payloads."""
