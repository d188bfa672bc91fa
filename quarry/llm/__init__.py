"""Training-data operators (`op1` to `op13`); nothing else in the library imports this subpackage."""
