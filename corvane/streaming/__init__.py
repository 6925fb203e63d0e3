"""Streams: builds that go on where they were broken off."""
