"""quillstat: authorship-signal text analytics as ordinary Spark jobs."""
