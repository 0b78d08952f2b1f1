"""Reading landing files and writing warehouse tables."""
