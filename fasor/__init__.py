"""fasor: hourly electrical-demand analytics written for Spark.

Every operator is a lazy ``DataFrame -> DataFrame`` function that works on all
equipments, tables and files at once.
"""
