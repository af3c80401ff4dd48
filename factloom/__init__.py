"""A Spark-native engine that builds, disambiguates and analyses a knowledge base of facts."""

__version__ = "0.1.0"
