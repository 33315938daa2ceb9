"""Captured HTML pages to an accumulated, de-duplicated record table, on Spark."""
