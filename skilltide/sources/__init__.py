"""Reading and writing: files, month layers, landed listings and pages, warehouse tables."""
