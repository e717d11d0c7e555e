"""How the operators are put together into layers."""
