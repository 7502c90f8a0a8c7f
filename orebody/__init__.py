"""Spark-native prospect intelligence: identity, evidence, ledgers, ranking and corpus hygiene as DataFrame operators."""
