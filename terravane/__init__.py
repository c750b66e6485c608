"""Spark-native cleaning, joining and sentiment scoring of environmental data.

Every operator takes DataFrames and returns DataFrames; nothing in the package
pulls table rows to the driver.
"""
