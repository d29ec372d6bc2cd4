"""tidemill: a Spark-native engine for curating harvested content."""
