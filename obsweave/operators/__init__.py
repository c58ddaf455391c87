"""DataFrame operators.  Each returns a lazy DataFrame unless its docstring says otherwise."""
