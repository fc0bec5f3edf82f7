"""User-behaviour and ad-click analytics as PySpark DataFrame transformations."""
