"""reelmill: Spark-native preparation of labelled media and event collections."""
