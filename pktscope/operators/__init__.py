"""pktscope operators."""
