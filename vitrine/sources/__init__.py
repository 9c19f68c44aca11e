"""Tables, exports and the stand-in inputs derived from the driver tables."""
