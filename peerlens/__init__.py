"""Spark-native engine that finds the members of a group which do not belong with the rest."""
