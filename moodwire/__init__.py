"""moodwire — message sentiment and escalation analytics on PySpark.

Every public operator is a ``DataFrame -> DataFrame`` transform built from
Catalyst expressions; Arrow-batched pandas code appears only where an
operator is inherently sequential (the escalation matcher) or calls an
external model.
"""

__version__ = "0.1.0"
