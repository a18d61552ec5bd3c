"""Batch operators: DataFrame -> DataFrame functions, all JVM-side."""
