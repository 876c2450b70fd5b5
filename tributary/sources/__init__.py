"""Reading and writing of landed files, layer tables and exports."""
