"""chatlake: a PySpark-native lake for append-only chat archives."""
