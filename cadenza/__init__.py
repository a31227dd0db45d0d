"""Cadenza: a Spark-native engine for annotated media corpora.

Every operator is a function ``DataFrame -> DataFrame`` or ``Column -> Column``; nothing here
starts a session, collects rows to the driver or caches on its own.
"""
