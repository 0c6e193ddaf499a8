"""pktscope plans."""
