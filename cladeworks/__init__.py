"""Spark-native genomic relatedness and SNP analytics."""
