"""Readers of seed lists, page bodies and review lists, and the writers that go with them."""
