"""Search-revenue attribution for web hit data, as Spark DataFrame functions and jobs."""
