"""pagegrain: catalogue data out of tables and streams of already fetched web pages, as Spark jobs."""
