"""Jobs and catalog definitions."""
