"""pktscope: network threat analytics as Spark DataFrame plans.

Packet captures become typed packet tables, event-time windows per
(source, destination), lexical features of HTTP request URIs, rule
labels, Spark ML detectors and evaluation tables.  Every operator is a
function ``DataFrame -> DataFrame`` (or a small job composing them);
nothing is collected to the driver except model-sized results.
"""

__version__ = "0.1.0"
