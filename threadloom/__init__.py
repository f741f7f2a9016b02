"""Support-conversation analytics as PySpark jobs.

The package turns flat, reply-linked posts into threads, profiles and clusters
the messages, retrieves similar threads, decides escalation, samples evaluation
sets, fits baselines, drives batched model calls and scores every system.  All
of it is DataFrame, SQL and Spark ML code.
"""

__version__ = "0.1.0"
