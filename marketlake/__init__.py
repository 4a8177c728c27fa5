"""marketlake: market-price analytics on a layered lake, written as Spark jobs."""
