"""DataFrame -> DataFrame operators; each works on batch and streaming frames where Spark allows."""
