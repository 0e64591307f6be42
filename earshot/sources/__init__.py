"""Tables and models: reading, checking, saving."""
