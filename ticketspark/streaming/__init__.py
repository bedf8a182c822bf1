"""Empty on purpose: the work covered here is batch only, with no stream, watermark or state."""
