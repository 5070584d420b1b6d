"""driftwell: Spark jobs for watching sliced tables and acting on what is seen."""
