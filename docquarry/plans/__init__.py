"""Whole flows composed from operators, and the queries registered with the driver."""
