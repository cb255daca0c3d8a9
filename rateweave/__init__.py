"""Rating-event analytics as composable Spark DataFrame operators.

Sub-packages:

``functions``  column expressions (no frame in sight)
``operators``  ``DataFrame -> DataFrame``; the window, event and alert ones
               work alike on static and on streaming frames
``sources``    readers, and adapters that shape other tables into ratings
``sinks``      batch writers
``streaming``  watermark, stream sinks, shared queries, progress
``plans``      whole jobs composed from the above
"""
