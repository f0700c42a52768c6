"""Part of mapweave; see the modules."""
