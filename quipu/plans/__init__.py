"""The commercial reports and the registry that dispatches them."""
