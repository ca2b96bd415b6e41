"""Spark-native engine for snapshots of versioned wide-column mutations."""
