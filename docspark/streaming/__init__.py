"""Imports that go on while files arrive."""
