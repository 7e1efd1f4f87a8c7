"""sluicework: a PySpark-native engine for table synchronisation, reconciliation and corpus preparation."""
