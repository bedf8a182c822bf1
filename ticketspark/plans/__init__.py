"""The whole flows, built from operators."""
