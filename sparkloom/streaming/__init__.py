"""The relay over a stream of targets."""
