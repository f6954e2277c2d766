"""Tables in and out of storage."""
