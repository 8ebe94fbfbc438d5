"""Checks of the library on the driver's commerce tables."""
