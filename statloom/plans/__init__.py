"""The concrete raw → bronze → silver → gold → indicators composition."""
