"""Cartolex: document collections to knowledge graphs on Spark, and queries over them."""
