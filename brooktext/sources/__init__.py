"""Tables, wire lines, delimited feeds and the shared work folder."""
