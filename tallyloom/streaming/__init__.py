"""Left empty on purpose.

The rebuilt workload has no streaming source, window or state. Stateless
operators (column selection, conditionals, keyword flags, a fitted recipe's
``bake``) are plain projections and therefore also run on a streaming
DataFrame; ``tests/test_streaming.py`` shows this.
"""
