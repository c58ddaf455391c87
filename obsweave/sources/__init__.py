"""Where data comes from: files, messages, brokers."""
