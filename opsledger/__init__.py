"""Operational analytics over orders, events, metrics and logs on Spark.

Every function takes and returns ``DataFrame``; nothing here starts a session,
and no operator collects rows to the driver.
"""
