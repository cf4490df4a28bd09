"""voxmill: a Spark engine that builds and analyses speech and text training data."""
