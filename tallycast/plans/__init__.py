"""Job composition and session helpers."""
