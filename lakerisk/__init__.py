"""Payment-risk analytics on a Raw/Bronze/Silver/Gold lake, as Spark DataFrame functions."""
