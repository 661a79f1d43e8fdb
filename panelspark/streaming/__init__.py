"""Streaming: intentionally empty.

The reference reads whole files once and has no watermark, window, session,
state or late-data logic, so there is no streaming operator to rebuild.
Everything in ``panelspark.operators`` is a DataFrame transformation and
therefore also applies to a streaming DataFrame where Spark allows it (for
example scoring a stream with a fitted Spark ML pipeline).
"""
