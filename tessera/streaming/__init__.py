"""Streaming: intentionally empty.

The reference has no stream source, watermark, window or stateful operator
(its only stream-like project is named in its README with no code), so there
is nothing to re-express with Structured Streaming.  All operators in this
package are plain DataFrame → DataFrame functions and can be applied to
micro-batches through ``foreachBatch`` if a caller needs that.
"""
