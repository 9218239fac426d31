"""PySpark-native record linkage engine"""
