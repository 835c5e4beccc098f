"""Table operators: `DataFrame -> DataFrame`, lazy unless a docstring says otherwise."""
