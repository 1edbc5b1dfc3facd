"""Spark-native analytics over GPU rental offers and spot-price history."""
