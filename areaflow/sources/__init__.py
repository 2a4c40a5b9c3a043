"""Reading and writing: header text files, snapshot directories, nested feeds, loads and manifests."""
