"""DataFrame-to-DataFrame operators; none of them acts, except where its docstring says so."""
