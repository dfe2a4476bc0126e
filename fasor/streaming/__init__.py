"""The folder load, run as files arrive."""
