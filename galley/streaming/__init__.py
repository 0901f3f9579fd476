"""The provider feed as a stream."""
