"""tierlens: a Spark-native engine for fetching, classifying and cleaning web text at scale."""
