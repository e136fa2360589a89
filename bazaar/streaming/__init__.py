from bazaar.streaming.incremental import stream_lead_counts, stream_review_sentiments  # noqa: F401
