from seqlake.cli import main

raise SystemExit(main())
