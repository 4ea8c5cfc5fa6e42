"""paylake: a Spark-native payments ETL and analytics engine.

Batch: raw string feed -> validation, first-copy de-duplication and a
reject funnel -> enrichment and flags -> fact table upsert with an audit
row -> staging view and marts. Streaming: fraud alerts, running metrics
and an event log on Structured Streaming, each with a batch twin.
"""

__version__ = "0.1.0"
