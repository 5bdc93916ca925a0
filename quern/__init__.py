"""A PySpark-native engine that turns document collections into clean question-answer datasets."""
