"""Web-event sessions, funnels and conversion reports as plain Spark DataFrame functions."""
