"""``DataFrame -> DataFrame`` operators for batch and streaming frames."""
