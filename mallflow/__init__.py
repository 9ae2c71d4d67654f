"""Indoor-positioning analytics on Spark: device pings in, footfall, dwell, rankings, heat maps and shop moves out."""
