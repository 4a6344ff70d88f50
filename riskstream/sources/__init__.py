"""Where transactions come from: message streams and tables."""
