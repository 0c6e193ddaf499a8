"""pktscope sources."""
