"""Column functions whose results do not depend on the session's time zone or number types."""
