"""Reading raw events, and writing and reading layers, versions and exports."""
