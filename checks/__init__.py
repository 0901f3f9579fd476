"""The supplied test tables as a restaurant source, and the registered queries over them."""
