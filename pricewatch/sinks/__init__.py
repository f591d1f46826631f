"""Writers: landed files, keyed messages, live views, result documents."""
