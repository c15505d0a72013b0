"""Audience analytics on Spark: marts, segments, outreach records and the sent ledger."""
